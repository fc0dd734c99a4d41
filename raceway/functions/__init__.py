from raceway.functions.columns import (
    day_number,
    endpoint_name,
    instant,
    mapped,
    whole_second,
    written_day,
)

__all__ = ["day_number", "endpoint_name", "instant", "mapped", "whole_second", "written_day"]
