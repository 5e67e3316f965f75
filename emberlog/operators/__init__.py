"""Operators: parsers, routing, bronze/silver/gold, serving loads, views."""
