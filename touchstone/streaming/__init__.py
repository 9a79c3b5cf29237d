from touchstone.streaming.weather import upsert_new_forecasts

__all__ = ["upsert_new_forecasts"]
