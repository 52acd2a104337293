"""The three runs a user starts: discover, observe, status."""
