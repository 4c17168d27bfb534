"""Query plans over the driver tables and shared physical-shape helpers.

Query modules register themselves when ``quarry.plans.catalog`` is imported
(``registry.all_queries`` does that), so helpers here can be imported by operators
without pulling in every query.
"""
