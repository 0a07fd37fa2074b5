"""Query plans: the stand-in flow, the query register and its SQL oracle."""
