"""Inputs: JSON transaction lines, reference lists, the events fixture."""
