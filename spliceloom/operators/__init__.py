"""operators of the spliceloom package."""
