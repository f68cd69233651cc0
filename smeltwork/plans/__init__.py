"""The three layers, the control table that drives them, and the audit trail they leave."""
