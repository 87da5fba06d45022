"""Reading deliveries and tables, writing tables."""
