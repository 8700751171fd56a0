"""All query modules of the core."""

from __future__ import annotations

from weftline.plans import composites, functions, relational, snapshots, storage

MODULES = [snapshots, relational, functions, composites, storage]
FLAGSHIP = composites.c01_trends
