"""Jobs that join the operators into runs."""
