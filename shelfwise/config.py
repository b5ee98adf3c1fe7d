"""Job parameters."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ListingConfig:
    """Parameters of the cleaning, ingestion and loading jobs.

    The defaults are fixed values of the feed's contract.
    """

    batch_rows: int = 50
    discount_fill: str = "median"  # anything else fills 0.0
    rating_min: float = 0.0
    rating_max: float = 5.0
    kafka_servers: str = "localhost:9092"
    kafka_topic: str = "raw_listings"
    kafka_starting_offsets: str = "earliest"
