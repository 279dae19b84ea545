"""functions of the spliceloom package."""
