"""Readers for the shipment master, reference tables and customer lists."""
