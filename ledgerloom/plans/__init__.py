"""The spending tables: typed layer, star schema, marts and the questions asked of them."""
