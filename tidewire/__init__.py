"""Event-intelligence analytics as plain ``DataFrame -> DataFrame`` functions."""

from tidewire.session import build_session, chain, scratch_dir

__all__ = ["build_session", "chain", "scratch_dir"]
