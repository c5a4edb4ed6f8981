"""Plan patterns that decide behaviour at scale: checked broadcasts, global
ranks without a single-partition exchange, prefix sums, hash-seeded bootstrap
weights."""
