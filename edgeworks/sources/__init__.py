"""Reading and writing of node and edge tables, and the fixtures built from the driver tables."""
