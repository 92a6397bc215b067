"""Operators for preparing language-model training data, their queries and the SQL that checks them."""
