"""The same row-wise cleaning over files as they arrive."""
