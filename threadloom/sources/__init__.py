"""Threadloom sources."""
