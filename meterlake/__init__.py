"""meterlake — daily ingest of power-quality measurements as Spark jobs.

Feeds (device registry, periodic and event measurements, CSV) are conformed
to one layout, combined, restricted to registered devices and added to a
partitioned table without duplicating stored keys.
"""

from meterlake.schemas import CANONICAL, CANONICAL_FEEDS, CANONICAL_LAYOUT, EVENT, PERIODIC, REGISTRY, Layout

__all__ = ["CANONICAL", "CANONICAL_FEEDS", "CANONICAL_LAYOUT", "EVENT", "Layout", "PERIODIC", "REGISTRY"]
