"""sources of the spliceloom package."""
