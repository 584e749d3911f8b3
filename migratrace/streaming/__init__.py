"""The row-wise operators on a streaming DataFrame."""
