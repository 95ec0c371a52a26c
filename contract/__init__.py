"""Wiring of the library to the driver: one query key per inventory item."""
