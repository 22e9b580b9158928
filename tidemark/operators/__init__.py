"""Pure DataFrame operators (no writes)."""
