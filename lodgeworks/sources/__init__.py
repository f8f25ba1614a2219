"""Scans, sinks and the bookings view."""
