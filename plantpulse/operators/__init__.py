"""Data operators: cleaning, repair, features, clustering and scoring."""
