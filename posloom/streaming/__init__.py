"""The weekly batch as incremental jobs: new files, weekly totals, run guard."""
