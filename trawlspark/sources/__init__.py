"""Tables, message files and queues."""
