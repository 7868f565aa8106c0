"""DataFrame operators of the master-data flow."""
