"""The loads: staging, dimensions, facts, marts, and the order they run in."""
