"""Reading raw station tables and writing results."""
