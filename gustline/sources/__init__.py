"""Tables, streams and the stand-in readings taken from the given tables."""
