"""DataFrame operators: split, quarantine, match, window, count, preview."""
