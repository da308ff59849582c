"""The three monthly jobs, each a composition of operators between scan and sink."""
