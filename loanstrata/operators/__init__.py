"""DataFrame → DataFrame operators shared by the jobs."""
