"""plans of the spliceloom package."""
