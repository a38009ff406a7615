"""Reading the landing folder, writing and registering tables."""
