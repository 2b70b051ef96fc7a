"""All registered queries."""

from __future__ import annotations

from gristmill.queries import base, corpus, policy, relational, sites  # noqa: F401  (importing registers)

REGISTRY = base.REGISTRY
