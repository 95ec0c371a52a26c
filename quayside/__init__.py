"""Quayside: order, product, customer and delivery analytics as Spark jobs."""
