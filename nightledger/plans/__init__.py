"""The wide feature plan and the registered queries."""
