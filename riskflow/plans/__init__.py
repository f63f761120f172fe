"""Jobs that chain operators between stored layers."""
