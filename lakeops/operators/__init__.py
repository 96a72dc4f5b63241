"""DataFrame -> DataFrame operators. Nothing here runs a job unless its name or docstring says so."""
