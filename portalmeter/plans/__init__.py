"""The dashboard reports and the monthly load, put together from the operators."""
