"""Whole tasks composed from the operators.

The pixels stay one lazy plan. Where a task first decides on frame keys, the key table is
written to the shared folder, so that its true size is known when the pixels meet it.
"""
