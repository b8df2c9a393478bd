"""Shipment and delivery-delay analytics as Spark DataFrame plans."""
