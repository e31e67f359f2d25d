"""Whole jobs: an account from feed to published rows, and all accounts at once."""
