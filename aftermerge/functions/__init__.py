"""Column-level building blocks: message text, identities and regular expressions."""
