"""Message streams and the area dimension."""
