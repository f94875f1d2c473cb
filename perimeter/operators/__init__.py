"""Building blocks of the reports, each a function over typed tables."""
