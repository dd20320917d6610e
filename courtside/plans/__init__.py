"""Table jobs built from the operators: the reference's models (M1-M23),
the gold marts, and the role bindings to the driver's test tables."""
