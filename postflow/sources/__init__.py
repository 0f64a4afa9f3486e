"""Reading and writing posts."""
