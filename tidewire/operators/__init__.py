"""Operators over tables: joins that fetch by key, and arrays as rows."""
