"""Developer tools: the result check and the comparison baseline."""
