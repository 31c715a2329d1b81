"""Independent check SQL for the registered queries."""
