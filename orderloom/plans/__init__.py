"""Named results over the star schema and the order lines."""
