"""Generic relational operators the exports and views are composed of."""
