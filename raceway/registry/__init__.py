from raceway.registry.oracles import ORACLES
from raceway.registry.queries import QUERIES, flagship

__all__ = ["ORACLES", "QUERIES", "flagship"]
