"""Tables, listings and sinks."""
