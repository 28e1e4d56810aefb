"""Registered queries over the provided tables, each with an equivalent SQL text where there is one."""
