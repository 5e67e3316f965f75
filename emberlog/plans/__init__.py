"""Multi-stage jobs and the registered queries."""
