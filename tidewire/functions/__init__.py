"""Pure functions on values and schemas."""
