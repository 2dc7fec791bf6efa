"""DataFrame -> DataFrame operators, loads and table maintenance."""
