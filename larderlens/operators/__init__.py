"""DataFrame operators: extraction, matching, roll-up, search and quality."""
