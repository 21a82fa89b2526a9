"""Table definitions, the daily refresh and the warehouse questions."""
