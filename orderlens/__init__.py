"""Customer analytics for e-commerce orders, written as Spark DataFrame operators.

``sources``    raw CSV contracts, versioned warehouse, published files, landing manifest
``functions``  column expressions: typed parsing, averages, coverage, display
``operators``  reusable DataFrame operators: exclusive prefix sum, ABC classes, exact group statistics
``plans``      star schema, marts, quality checks, publication, measures, the pipeline
"""
