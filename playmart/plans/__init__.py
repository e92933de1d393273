"""Named relations and reports composed from the operators."""
