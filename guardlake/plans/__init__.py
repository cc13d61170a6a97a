"""Example jobs over the given tables, and how those tables become operator inputs."""
