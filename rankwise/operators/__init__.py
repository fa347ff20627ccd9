"""Analyses over ranked lists: popularity, distribution, lists, itemsets, quality."""
