"""Fuse many time-of-day stamped logs of one recorded session into one wide, time-ordered table."""

from logbraid.plans.integrate import Integration, integrate

__all__ = ["Integration", "integrate"]
