from .warehouse import Warehouse, conform

__all__ = ["Warehouse", "conform"]
