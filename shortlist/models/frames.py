"""Batches of rows that hold whole groups."""

from ..operators.frames import BATCH, whole_groups

__all__ = ["BATCH", "whole_groups"]
