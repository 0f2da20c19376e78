"""A local API to test and measure against."""
