"""Cleaning pipelines, the warehouse load, views and business queries."""
