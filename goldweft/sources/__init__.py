"""Inputs and outputs: message sources, bronze, golden store, relational tables, CSV."""
