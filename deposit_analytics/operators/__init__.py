"""DataFrame-to-DataFrame steps the jobs are built from."""
