"""Report plans: the 30 KPI result sets (K01-K30) and one runnable plan per
operator of the inventory, each a function ``(Catalog, RunParams) -> DataFrame``."""
