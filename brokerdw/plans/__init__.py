"""Data products of the brokerage warehouse and the runs that load them."""
