"""Scans: raw landing files, hour-slot addressing, metadata snapshots, fixtures."""
