"""Parameterised plans: the customer entity, derived test inputs, the
registered queries and their SQL oracles."""
