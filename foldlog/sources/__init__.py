"""Frames from tables, files and exports."""
