"""Reading inputs and keeping state."""
