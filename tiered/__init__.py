"""Tiered incident analytics: snapshots, subject tables, marts, reports, models."""

__version__ = "0.1.0"
