"""Settings, the state machine, tracks, and the registered queries."""
