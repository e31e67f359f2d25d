"""Readers. Workbooks and text become a grid of cells; tables stay tables."""
