"""Reports and the end-to-end run, composed from the operators."""
