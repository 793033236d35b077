"""Strategies, checks and gates."""

from .strategies import next_state, plan_change

__all__ = ["next_state", "plan_change"]
