"""Where the twelve source relations come from."""
