"""A PySpark-native engine for parcel, raster-block and catalog tables.

``operators``  relational operators as DataFrame builders
``functions``  scalar column builders and geometry / array kernels
``sources``    readers, writers and their contracts
``plans``      whole queries composed of the operators above
``streaming``  incremental and streaming runs
"""
