"""Routeweave: multi-leg trip search expressed as Spark DataFrame plans.

Requests (coordinates, date, price and travel-time ranges) are answered
with their cheapest itineraries over catalogues of cities, places
(airports, bus stations) and priced trips.  Every step is a built-in
column expression or a relational operator, so Catalyst plans it and
all requests of a batch are searched together.
"""

from routeweave.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
