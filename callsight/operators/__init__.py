from callsight.operators import calls, fees

__all__ = ["calls", "fees"]
