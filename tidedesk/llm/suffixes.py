"""Suffix sorting by linear grouping of Lyndon prefixes.

Phase 1 groups suffixes by their longest Lyndon prefix. At first a suffix's group is its first character. Groups are
settled in descending order: a member that is followed by a settled suffix of a higher group takes that suffix's
prefix behind its own and moves up behind the members that do not; a member followed by a lower group is settled, as
what follows it is its next smaller suffix. Groups are named by the place where they begin in the final order, so a
split renames nothing else. All groups whose members wait for no unsettled one are settled at the same time, and others
are not looked at until then.

Phase 2 emits the order of each group from that of the suffixes its members follow as next smaller ones: they are lower,
so their places are known first. A member behind which its own prefix comes again goes by the last of the run, shorter
runs first, as what follows a run is lower than the prefix. A group of one member is at its place already, and all groups
that wait for none are emitted at the same time.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

_SETTLED, _SAME, _READY = 0, 1, 2


def _members(groups: np.ndarray, size: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places of the members of some groups, and of each its group and its suffix."""
    sizes = size[groups]
    own = np.repeat(groups, sizes)
    places = own + np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return places, own, members[places]


def lyndon_groups(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group and the Lyndon prefix's length of every suffix of ``text``, which ends with a 0.

    Zeros are sentinels: lower than all else, and no prefix reaches across one.
    """
    n = len(text)
    counts = np.bincount(text)
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    group, length = starts[text].astype(np.int64), np.ones(n, np.int64)
    settled = text == 0
    # The members of a group stand together, from the place that names it.
    members, size = np.argsort(text, kind="stable"), np.zeros(n, np.int64)
    size[starts[counts > 0]] = counts[counts > 0]
    fresh = starts[1:][counts[1:] > 0]
    open_groups = np.zeros(0, np.int64)
    waiting, awaited = np.zeros(0, np.int64), np.zeros(0, np.int64)
    blocked, status = np.zeros(n, bool), np.zeros(n, np.int8)
    while len(fresh) or len(open_groups):
        _, own, at = _members(fresh, size, members)
        follower = at + length[at]
        waits = group[follower] > own
        waiting, awaited = np.concatenate((waiting, own[waits])), np.concatenate((awaited, follower[waits]))
        still = ~settled[awaited]
        waiting, awaited = waiting[still], awaited[still]
        open_groups = np.concatenate((open_groups, fresh))
        blocked[waiting] = True
        held = blocked[open_groups]
        blocked[waiting] = False
        free, open_groups = np.sort(open_groups[~held]), open_groups[held]
        places, own, at = _members(free, size, members)
        follower = at + length[at]
        theirs = group[follower]
        up, same = theirs > own, theirs == own
        status[at] = np.where(up, _READY, np.where(same, _SAME, _SETTLED))
        key = np.where(up, theirs + 2, 0)
        # A run of equal prefixes goes the way of its last member.
        end = follower[same]
        while len(on := np.nonzero(status[end] == _SAME)[0]):
            end[on] += length[end[on]]
        key[same] = np.where(status[end] == _READY, 1, 0)
        length[at[up]] += length[follower[up]]
        settled[at[key == 0]] = True
        order = np.argsort((own << 32) | key)
        at, key = at[order], key[order]
        parts = np.nonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (key[1:] != key[:-1]))))[0]
        sizes = np.diff(parts, append=len(own))
        names = places[parts]
        members[places], size[names] = at, sizes
        group[at] = np.repeat(names, sizes)
        fresh = names[key[parts] != 0]
    return group, length


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The order of all suffixes of ``text``, non-negative integers ending with 0. Zeros count as distinct, in order."""
    group, length = lyndon_groups(text)
    n = len(text)
    zeros = np.nonzero(text == 0)[0]
    place = np.full(n, -1, np.int64)
    place[zeros] = np.arange(len(zeros))
    size, members = np.bincount(group, minlength=n), np.argsort(group, kind="stable")
    alone = (size[group] == 1) & (text != 0)
    place[alone] = group[alone]
    open_groups = np.nonzero(size > 1)[0]
    open_groups = open_groups[text[members[open_groups]] != 0]
    _, waiting, at = _members(open_groups, size, members)
    # The next smaller suffix behind a run of equal prefixes, and the run's length; both double while they grow.
    behind, run = np.arange(n) + length, np.ones(n, np.int64)
    behind[zeros] = zeros
    on = at[group[behind[at]] == waiting]
    while len(on):
        run[on], behind[on] = run[on] + run[behind[on]], behind[behind[on]]
        on = on[group[behind[on]] == group[on]]
    awaited, blocked = behind[at], np.zeros(n, bool)
    while len(open_groups):
        still = place[awaited] < 0
        waiting, awaited = waiting[still], awaited[still]
        blocked[waiting] = True
        held = blocked[open_groups]
        blocked[waiting] = False
        free, open_groups = open_groups[~held], open_groups[held]
        places, own, at = _members(free, size, members)
        place[at[np.lexsort((run[at] * n + place[behind[at]], own))]] = places
    order = np.empty(n, np.int64)
    order[place] = np.arange(n)
    return order


cloudpickle.register_pickle_by_value(sys.modules[__name__])
