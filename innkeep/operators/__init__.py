"""DataFrame operators shared by the marts."""
