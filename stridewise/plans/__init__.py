"""Plans: the cleaning pipeline, the end-to-end run and the job entry point."""
