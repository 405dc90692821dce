"""Threadloom functions."""
