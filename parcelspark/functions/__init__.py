"""See the package docstring of :mod:`parcelspark`."""
