"""streaming of the spliceloom package."""
