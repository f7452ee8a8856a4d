"""Job descriptions, transform plans, load fan-out and the run log."""
