"""Graph operators over weekly edge tables ``(time_week, src, dst, n_tx)``."""
