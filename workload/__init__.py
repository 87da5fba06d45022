"""The driver's test tables seen as payments, and the queries over them."""
