"""Column functions: angles, quaternions, rotations, map projections, cameras, packed keys, text."""
