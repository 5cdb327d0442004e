"""Sources: exchange page normalisers and the driver-table fixture views."""
