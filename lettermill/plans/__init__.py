"""Jobs of more than one step."""
