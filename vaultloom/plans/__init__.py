"""The table jobs: cleaning, staging, vault, and the ordered load."""
