"""Running, watching and stopping streaming queries."""
